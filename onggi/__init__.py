"""onggi: a Spark-first engine for preparing and auditing language-model text data."""
