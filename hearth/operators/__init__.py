"""DataFrame operators: clean steps, search, integrity rules, upsert, profiles, quantiles."""
