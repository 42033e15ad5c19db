"""The queries registered with the driver, by topic."""
