"""tallyspark: Spark-native corpus, lending-language and credit analytics.

Every rule is a Column expression (``tallyspark.functions``) applied to a whole
table; jobs and reports on top of them live in ``tallyspark.operators``.
"""

__version__ = "0.1.0"
