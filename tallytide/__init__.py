"""Time-course count-matrix analytics as Spark DataFrame operators.

``sources``    reading and writing matrices, metadata, annotations and result tables
``functions``  column expressions
``operators``  single steps, ``DataFrame -> DataFrame``
``plans``      the pipelines users call: ingest, normalise, compare, project, cluster
"""
