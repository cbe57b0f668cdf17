"""Sales and customer reports over retail order tables, as Spark DataFrame functions."""
