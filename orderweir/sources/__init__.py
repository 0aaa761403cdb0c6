"""Where rows come from: landing tables, order events, change events, connectors."""
