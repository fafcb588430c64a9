"""corpusloom: a Spark-native engine that turns raw sources into language-model training data."""
