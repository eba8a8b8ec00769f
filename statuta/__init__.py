"""statuta: Spark-native annotation and analytics for large collections of marked-up documents."""
