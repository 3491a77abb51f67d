"""studyloom: a Spark-native engine that turns study documents into clean relational tables."""
