"""tickspark: Spark-native operators for time-stamped event feeds."""
