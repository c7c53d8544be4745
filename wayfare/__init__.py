"""Visit analytics and place recommendation as plain PySpark DataFrame functions."""
