"""Drug-safety signal analytics as lazy Spark plans."""
