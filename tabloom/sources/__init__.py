"""Role headers, typed tables, fitted-statistics files, training logs and batch draws."""
