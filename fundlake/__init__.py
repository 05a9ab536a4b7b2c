"""fundlake: fund and investor analytics expressed as Spark DataFrame plans."""
