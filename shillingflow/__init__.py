"""Mobile-money payment analytics expressed as Spark jobs."""
