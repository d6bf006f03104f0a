"""Query catalogue: the given test tables recast into the model, the Spark
queries (one per SURVEY §7.3 key) and their independent SQL oracles."""
