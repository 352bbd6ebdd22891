"""Job chains: the catalogue queries, their oracle SQL, the batch pipeline."""
