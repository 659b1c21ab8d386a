"""Player- and event-level sports analytics as Spark DataFrame operators."""
