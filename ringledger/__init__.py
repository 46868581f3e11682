"""ringledger: telecom billing and activity analytics expressed as Spark DataFrames."""
