"""Entity resolution and record linkage expressed as Spark DataFrame plans."""
