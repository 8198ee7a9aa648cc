"""DataFrame operators: selection, batching, regrouping, updates, reports and search."""
