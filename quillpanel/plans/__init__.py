"""Driver-side planning: mapping sheets, the reduction language, pipelines, the query catalogue."""
