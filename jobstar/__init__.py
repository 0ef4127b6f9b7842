"""jobstar: Spark-native job-postings star schema builder.

Layers: ``sources`` (readers and sinks), ``functions`` (Column -> Column
cleaning expressions), ``operators`` (DataFrame -> DataFrame building
blocks), ``plans`` (bronze/silver/gold stages and the driver query
catalog) and ``streaming`` (incremental bronze landing).
"""

__version__ = "0.1.0"
