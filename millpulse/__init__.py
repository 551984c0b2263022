"""Machine telemetry and production-order analytics as plain PySpark DataFrame functions."""
