"""Exact polygon functions: thin JVM functions on the geometry library that ships with Spark.

`register(spark)` compiles `java/Geo.java` once for a session, stores the archive in the shared folder and adds
it to the session; executors get it from there and no Python worker is involved. Without a compiler it
raises, and everything on rectangles works as before.
"""

from __future__ import annotations

import hashlib
import io
import os
import shutil
import subprocess
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession
from pyspark.sql import types as T

from tesserae.storage import scratch, write_bytes

SOURCE = Path(__file__).parent / "java" / "Geo.java"
BIN, NUM, YES = T.BinaryType(), T.DoubleType(), T.BooleanType()
#: A pair that meets: see Geo.Meet.
MET = T.StructType([T.StructField("l", T.LongType()), T.StructField("r", T.LongType()), T.StructField("shared", NUM), T.StructField("area_l", NUM), T.StructField("area_r", NUM), T.StructField("geometry", BIN)])
FUNCTIONS = {
    "Area": NUM, "Length": NUM, "IsValid": YES, "IsEmpty": YES, "MakeValid": BIN, "Centroid": BIN, "Bounds": T.ArrayType(NUM), "Parts": T.ArrayType(BIN),
    "Intersection": BIN, "Difference": BIN, "Union": BIN, "Intersects": YES, "Contains": YES, "Distance": NUM, "Iou": NUM, "Buffer": BIN, "Scale": BIN, "Rectangle": BIN,
    "Meet": T.ArrayType(MET), "Subdivide": T.ArrayType(BIN), "CentroidXY": T.ArrayType(NUM), "Affine": BIN, "Polygonal": BIN, "Clip": BIN,
}


def archive(spark: SparkSession) -> bytes:
    """The compiled classes as an archive. The class path is the driver's own: Python may have taken pyspark from
    a zip that holds no jars."""
    jvm_path = spark._jvm.java.lang.System.getProperty("java.class.path")
    javac = shutil.which("javac") or str(Path(os.environ.get("JAVA_HOME", "/nowhere")) / "bin" / "javac")
    if not Path(javac).exists():
        raise RuntimeError("polygon functions need a Java compiler on the driver")
    with tempfile.TemporaryDirectory(prefix="tesserae-geo-") as work:
        options = Path(work) / "options"
        options.write_text(f'-cp\n"{jvm_path}"\n'.replace("\\", "\\\\"))
        out = Path(work) / "classes"
        done = subprocess.run([javac, "-nowarn", f"@{options}", "-d", str(out), str(SOURCE)], capture_output=True, text=True)
        if done.returncode:
            raise RuntimeError(f"polygon functions don't compile: {done.stderr[-2000:]}")
        packed = io.BytesIO()
        with zipfile.ZipFile(packed, "w", zipfile.ZIP_DEFLATED) as jar:
            for f in sorted(out.rglob("*.class")):
                jar.write(f, f.relative_to(out).as_posix())
        return packed.getvalue()


def register(spark: SparkSession) -> None:
    """Makes geo_area, geo_intersection, geo_buffer and so on, and the aggregate geo_union_of, known to the session;
    compiled once in it."""
    mark = hashlib.sha256(SOURCE.read_bytes()).hexdigest()
    if spark.conf.get("tesserae.geo", None) == mark:
        return
    path = f"{scratch(spark, 'geo')}.jar"
    write_bytes(spark, path, archive(spark))
    spark.sql(f"ADD JAR '{path}'")
    for name, kind in FUNCTIONS.items():
        spark.udf.registerJavaFunction(f"geo_{name.lower()}", f"tesserae.Geo${name}", kind)
    session, functions = spark._jsparkSession, spark._jvm.org.apache.spark.sql.functions
    union = session.artifactManager().classloader().loadClass("tesserae.Geo$UnionOf").getDeclaredConstructors()[0]
    made = union.newInstance(spark.sparkContext._gateway.new_array(spark._jvm.java.lang.Object, 0))
    session.udf().register("geo_union_of", functions.udaf(made, spark._jvm.org.apache.spark.sql.Encoders.BINARY()))
    spark.conf.set("tesserae.geo", mark)
