"""End-to-end plans and the queries registered with the driver."""
