"""Spark-native screening of training corpora: rows in, decisions out."""
