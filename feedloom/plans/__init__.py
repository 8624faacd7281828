"""Worked plans: the property example, its inputs from the driver tables, and the registered queries."""
