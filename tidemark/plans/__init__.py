"""End-to-end plans (validation, drift report, snapshot, migration plan), the domain schema, and the registered queries with their SQL oracle."""
