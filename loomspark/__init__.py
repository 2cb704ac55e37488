"""A Spark-native engine for curating and evaluating corpora of ORM code and the SQL it emits."""
