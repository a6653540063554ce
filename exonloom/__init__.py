"""exonloom: genome-annotation analytics written as Spark DataFrame jobs."""
