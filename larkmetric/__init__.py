"""Marketing attribution and customer value on PySpark.

Every operator takes and returns a DataFrame built from native Spark
expressions; Catalyst plans the whole and nothing is collected on the driver.
"""
