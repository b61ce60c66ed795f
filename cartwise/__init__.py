"""cartwise: recommendation analytics expressed as Spark DataFrame jobs."""
