"""DataFrame → DataFrame operators: cleaning, day stats, rules, anomalies, incidents, reports."""
