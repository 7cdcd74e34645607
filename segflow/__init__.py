"""segflow: ADT (HL7 v2) envelope flattening on Spark."""

__version__ = "0.1.0"
