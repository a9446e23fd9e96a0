"""A Spark-native engine for legislative records and the text they carry."""
