"""Gene-fusion analytics expressed as Spark DataFrame operators."""
