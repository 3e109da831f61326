"""sparksift: web-domain discovery, classification and reporting on PySpark DataFrames."""
