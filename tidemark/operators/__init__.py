"""DataFrame-in, DataFrame-out operators: checks, contracts, drift, render, migrations, lint, search, integrity."""
