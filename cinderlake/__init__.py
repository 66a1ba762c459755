"""A Spark-native engine for wildfire-perimeter histories, with operators for training corpora."""
