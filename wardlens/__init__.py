"""wardlens: DataFrame operators for patient-encounter tables on Apache Spark."""
