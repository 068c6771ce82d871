"""corpusloom: source-corpus curation and chat-record operators for Spark.

Every operator is a plain ``DataFrame -> DataFrame`` function (or a ``Column`` builder), so jobs
are written as ``df.transform(op)`` chains and Catalyst sees one logical plan.
"""

__version__ = "0.1.0"
