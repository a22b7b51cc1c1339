"""Analytics over multi-view scene collections on Spark."""
