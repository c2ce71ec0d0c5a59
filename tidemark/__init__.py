"""Point-in-time market data as plain DataFrame-to-DataFrame functions on Spark."""
