"""corpusloom: text-corpus curation, leakage control and detector evaluation on Spark."""
