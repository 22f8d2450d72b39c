"""Named plans: reports, telemetry and the registry of queries."""
