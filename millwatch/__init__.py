"""millwatch: sensor analytics and predictive maintenance on PySpark."""
