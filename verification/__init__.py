"""Grid tables derived from the driver's test data, the registered queries, and their independent SQL."""
