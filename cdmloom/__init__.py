"""Clinical-vocabulary ETL into the OMOP Common Data Model v5.4, written as Spark DataFrame jobs."""
