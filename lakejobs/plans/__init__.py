"""Gold marts, end-to-end jobs and the queries registered with the driver."""
