"""End-to-end data products and the driver-table queries."""
