"""Motor-insurance claim analytics as Spark DataFrame programs."""
