"""The layered models: bronze views, silver dimensions and fact, gold summaries."""
