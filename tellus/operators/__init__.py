"""DataFrame -> DataFrame operators. All are lazy plans; none collects data."""
