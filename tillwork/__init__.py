"""tillwork: retail data preparation and reporting as PySpark DataFrame operators."""
