"""Operations of a large-scale training-data pipeline, as Spark jobs.

Each module holds one operator with its own general interface; ``queries`` binds
them to the tables. Nothing outside this folder imports it.
"""
