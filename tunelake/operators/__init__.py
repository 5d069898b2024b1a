"""DataFrame -> DataFrame operators: cleaning, quality constraints,
analyses, exploitation sets and ML data preparation."""
