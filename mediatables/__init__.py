"""mediatables: media analytics on Spark.

Subpackages:
    functions  column expressions (redaction, tagging, rules, vectors, imaging)
    operators  DataFrame operators (kNN, IVF, emotion, signal, faces, maintenance, models)
    sources    readers, sinks, content fetch, filesets
    plans      query surface, batch jobs, stand-in queries for the shared tables
    streaming  incremental ingest
"""
