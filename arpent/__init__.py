"""arpent: property-market analytics as Spark DataFrame operators."""
