"""Road-traffic analytics on vehicle passages as Spark DataFrame operators."""
