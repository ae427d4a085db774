"""tarmac: aircraft surveillance (ADS-B / Mode-S) analytics as PySpark DataFrame jobs."""
