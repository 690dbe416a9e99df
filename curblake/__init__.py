"""curblake: a Spark-native engine for semi-structured curb regulations."""
