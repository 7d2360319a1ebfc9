"""Ad-auction funnel analytics as Spark DataFrame operators and streaming jobs."""
