"""Training-data pipeline operators on Spark; nothing else in the library imports this folder."""
