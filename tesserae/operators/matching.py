"""Detections against ground truth: matching, metrics, calibration."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tesserae.functions import rect
from tesserae.operators import overlay, spatial
from tesserae.storage import store

#: Lower and upper edges of the calibration bins: fixed values, as repeated addition of 0.1 gives them.
BIN_EDGES = [
    (0.0, 0.1), (0.1, 0.2), (0.2, 0.30000000000000004), (0.30000000000000004, 0.4), (0.4, 0.5), (0.5, 0.6),
    (0.6000000000000001, 0.7000000000000001), (0.7000000000000001, 0.8), (0.8, 0.9), (0.9, 1.0),
]


def tagged(dets: DataFrame, labels: DataFrame, cell: float, iou_min: float = 0.25, area_min: float | None = None, year_safe: bool = False, met=None, area: Column | None = None) -> DataFrame:
    """tag, det_id, label_id, iou, det_class, label_class of every detection and label that is in a set:

    TP and 'wrong class' are detections whose best label of the same year overlaps enough and has no better
    detection; FP are detections that meet no label of any year, or no label enough; FN are labels
    likewise. A detection that meets only labels of other years is in no set, unless year_safe asks for the
    corrected form. Rows below area_min are 'small polygon' and take no part. Detections count classes from
    0, labels from 1. `met` makes the meetings of other shapes than rectangles, `area` is their area; meetings
    are read several times and stored."""
    area = rect.area() if area is None else area
    parts = []
    if area_min is not None:
        parts = [_small(dets, "det", area_min, area), _small(labels, "label", area_min, area)]
        dets, labels = dets.where(area >= area_min), labels.where(area >= area_min)
    met, _ = store((met or _met)(dets, labels, cell).select("det_id", "label_id", "det_class", "label_class", "year_det", "year_label", "iou"), "met")
    same = met.where("year_det = year_label")
    by_det = Window.partitionBy("det_id").orderBy(F.col("iou").desc(), "label_id")
    best = same.withColumn("n", F.row_number().over(by_det)).where("n = 1").drop("n")
    by_label = Window.partitionBy("label_id", "year_det").orderBy(F.col("iou").desc(), "det_id")
    found = best.where(F.col("iou") >= iou_min).withColumn("n", F.row_number().over(by_label)).where("n = 1")
    hit = found.select(F.when(F.col("label_class") == F.col("det_class") + 1, "TP").otherwise("wrong class").alias("tag"), "det_id", "label_id", rect.rint(F.col("iou"), 3).alias("iou"), "det_class", "label_class")
    seen = same if year_safe else met
    base = lambda d, key: d.join(seen.select(key).distinct(), key, "left_anti").union(d.join(same.select(key).distinct(), key, "left_semi"))
    none = lambda c, t: F.lit(None).cast(t).alias(c)
    fp = base(dets.select("det_id", "det_class"), "det_id").join(found.select("det_id"), "det_id", "left_anti").select(F.lit("FP").alias("tag"), "det_id", none("label_id", "long"), none("iou", "double"), "det_class", none("label_class", "int"))
    fn = base(labels.select("label_id", "label_class"), "label_id").join(found.select("label_id"), "label_id", "left_anti").select(F.lit("FN").alias("tag"), none("det_id", "long"), "label_id", none("iou", "double"), none("det_class", "int"), "label_class")
    out = hit.unionByName(fp).unionByName(fn)
    for p in parts:
        out = out.unionByName(p)
    return out


def _met(dets: DataFrame, labels: DataFrame, cell: float) -> DataFrame:
    """Every meeting of a detection and a label, with classes, years and overlap."""
    of = lambda side, c: F.col(f"{side}.{c}").alias(c)
    return spatial.pairs(dets, labels, cell).select(*(of("l", c) for c in ("det_id", "det_class", "year_det")), *(of("r", c) for c in ("label_id", "label_class", "year_label")), rect.iou("l.", "r.").alias("iou"))


def _small(df: DataFrame, what: str, area_min: float, area: Column) -> DataFrame:
    """The rows of df that are too small to take part, in the columns of `tagged`."""
    types = {"det_id": "long", "label_id": "long", "iou": "double", "det_class": "int", "label_class": "int"}
    own = (f"{what}_id", f"{what}_class")
    columns = (F.col(c) if c in own else F.lit(None).cast(t).alias(c) for c, t in types.items())
    return df.where(area < area_min).select(F.lit("small polygon").alias("tag"), *columns)


def with_dataset(tags: DataFrame, dets: DataFrame, labels: DataFrame) -> DataFrame:
    """tags with the dataset of the detection, or of the label where there is no detection."""
    both = with_sides(tags, dets.select("det_id", F.col("dataset").alias("__d")), labels.select("label_id", F.col("dataset").alias("__l")))
    return both.withColumn("dataset", F.coalesce("__d", "__l")).drop("__d", "__l")


def with_sides(tags: DataFrame, dets: DataFrame, labels: DataFrame) -> DataFrame:
    """tags with the columns of its detection and of its label, null where it has none. Tags without one would all go to one
    task: their part of the key, which nothing else has, deals them out by the other side's identifier. For other rows it is
    0, as a remainder, since a constant would be taken out of the key."""
    own = tags.withColumns({"__no_det": F.when(F.col("det_id").isNull(), F.col("label_id")), "__no_label": F.when(F.col("label_id").isNull(), F.col("det_id"))})
    out = own.withColumns({"__no_det": F.coalesce("__no_det", F.lit(0)), "__no_label": F.coalesce("__no_label", F.lit(0))})
    for other, key, part in ((dets, "det_id", "__no_det"), (labels, "label_id", "__no_label")):
        out = out.join(other.withColumn(part, F.pmod(F.col(key), F.lit(1)).cast("long")), [key, part], "left")
    return out.select(*tags.columns, *(c for d, k in ((dets, "det_id"), (labels, "label_id")) for c in d.columns if c != k))


def class_counts(tags: DataFrame, classes: DataFrame, by: list[str] = ()) -> DataFrame:
    """by, label_class, tp, fp, fn. A wrong class is a false positive of the class detected and a false
    negative of the label's class. Every group that occurs has a row for each class."""
    rows = tags.select(*by, F.explode(F.array(
        F.struct(F.when(F.col("tag").isin("TP", "FN", "wrong class"), F.col("label_class")).alias("k"), F.when(F.col("tag") == "TP", "tp").otherwise("fn").alias("what")),
        F.struct(F.when(F.col("tag").isin("FP", "wrong class"), F.col("det_class") + 1).alias("k"), F.lit("fp").alias("what")))).alias("x")).select(*by, "x.*").where("k IS NOT NULL")
    counts = rows.groupBy(*by, F.col("k").alias("label_class")).agg(*(F.count_if(F.col("what") == w).alias(w) for w in ("tp", "fp", "fn")))
    wanted = classes.select("label_class")
    if by:  # a row for each class and group
        every = wanted.agg(F.collect_set("label_class").alias("__k")).withColumn("__one", F.lit(1))  # one row, as long as there are classes
        wanted = tags.select(*by).distinct().withColumn("__one", F.lit(1)).join(F.broadcast(every), "__one").select(*by, F.explode("__k").alias("label_class"))
    return wanted.join(counts, [*by, "label_class"], "left").select(*by, "label_class", *(F.coalesce(w, F.lit(0)).alias(w) for w in ("tp", "fp", "fn")))


def _ratio(a, b):
    return F.coalesce(F.try_divide(a.cast("double"), b.cast("double")), F.lit(0.0))


def class_metrics(counts: DataFrame) -> DataFrame:
    """counts with precision, recall, f1; 0 where there is no true positive."""
    tp, fp, fn = F.col("tp"), F.col("fp"), F.col("fn")
    return counts.select("*", _ratio(tp, tp + fp).alias("precision"), _ratio(tp, tp + fn).alias("recall"), _ratio(2 * tp, 2 * tp + fp + fn).alias("f1"))


def averages(metrics: DataFrame, method: str = "micro-average", by: list[str] = ()) -> DataFrame:
    """One row, or one for each group: accuracy, precision, recall, f1. 'macro-weighted-average' weighs classes by their labels and
    then divides by the number of classes once more, as the established figures do. Accuracy is null when
    there is nothing to count."""
    tp, fp, fn = (F.sum(c) for c in ("tp", "fp", "fn"))
    if method == "micro-average":
        p, r = _ratio(tp, tp + fp), _ratio(tp, tp + fn)
    elif method == "macro-average":
        p, r = F.avg("precision"), F.avg("recall")
    elif method == "macro-weighted-average":
        w = F.col("tp") + F.col("fn")
        p, r = (_ratio(F.sum(F.col(c) * w), F.sum(w)) / F.count(F.lit(1)) for c in ("precision", "recall"))
    else:
        raise ValueError(f"unknown method {method!r}")
    one = metrics.groupBy(*by).agg(F.try_divide(tp.cast("double"), (tp + fp + fn).cast("double")).alias("accuracy"), p.alias("precision"), r.alias("recall"))
    return one.withColumn("f1", F.coalesce(F.try_divide(2 * F.col("precision") * F.col("recall"), F.col("precision") + F.col("recall")), F.lit(0.0)))


def geometric_metrics(dets: DataFrame, labels: DataFrame, by: list[str], cell: int) -> DataFrame:
    """by, iou, geom_precision, geom_recall, area_error of the unions of detections and labels."""
    d = overlay.union_area(dets, by, cell).withColumnRenamed("area", "det_area")
    lab = overlay.union_area(labels, by, cell).withColumnRenamed("area", "label_area")
    common = overlay.intersection(dets, labels, cell, [(c, c) for c in by]).select(*(F.col(f"l.{c}").alias(c) for c in by), *rect.SIDES)
    common, _ = store(common, "common")
    both = overlay.union_area(common, by, cell).withColumnRenamed("area", "both")
    j = d.join(lab, by).join(both, by, "left").withColumn("both", F.coalesce("both", F.lit(0)).cast("double"))
    return j.select(*by, F.try_divide("both", F.col("det_area") + F.col("label_area") - F.col("both")).alias("iou"), F.try_divide("both", "det_area").alias("geom_precision"), F.try_divide("both", "label_area").alias("geom_recall"), F.try_divide((F.col("det_area") - F.col("label_area")).cast("double"), F.col("label_area")).alias("area_error"))


def calibration(dets: DataFrame, score: str = "score", right: str = "is_right") -> DataFrame:
    """lower, upper, n, share of right rows in each half-open bin (lower, upper] that has rows."""
    bins = dets.sparkSession.createDataFrame(BIN_EDGES, "lower double, upper double")
    return dets.join(F.broadcast(bins), (F.col(score) > F.col("lower")) & (F.col(score) <= F.col("upper"))).groupBy("lower", "upper").agg(F.count(F.lit(1)).alias("n"), F.avg(F.col(right).cast("double")).alias("share"))


def write_metrics(metrics: DataFrame, path: str, overwrite: bool = True) -> None:
    """Metrics as CSV with a header, numbers in full."""
    metrics.write.mode("overwrite" if overwrite else "ignore").option("header", "true").csv(path)


def read_metrics(spark, path: str, schema) -> DataFrame:
    return spark.read.option("header", "true").schema(schema).csv(path)
