"""End-to-end loads, and the queries registered with the driver."""
