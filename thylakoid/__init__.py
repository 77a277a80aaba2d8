"""thylakoid: organelle-genome quality analytics expressed as Spark plans."""
