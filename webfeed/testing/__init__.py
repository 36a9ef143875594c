"""Test tooling: writes deliveries derived from the driver's ``events`` table."""
