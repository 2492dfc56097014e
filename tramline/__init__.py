"""PySpark-native analytics over public-transport feeds and training-data corpora."""
