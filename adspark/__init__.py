"""adspark: TV-advertising measurement as Spark DataFrame jobs."""
