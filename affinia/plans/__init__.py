"""End-to-end jobs, table bindings and the registered queries."""
