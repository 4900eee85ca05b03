"""Job compositions (ingest, training, serving report, producer, scoring) and the
stand-in adapters that map the driver's test tables onto the operators' column roles."""
