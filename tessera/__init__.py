"""Tessera: a PySpark-native taxonomy retrieval and corpus engine."""
