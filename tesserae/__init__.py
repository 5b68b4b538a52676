"""Tesserae: Spark-first analytics over polygon detections, plus corpus operators in ``tesserae.llm``."""
