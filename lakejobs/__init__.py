"""Event and change-log lake jobs written with the Spark DataFrame API."""
