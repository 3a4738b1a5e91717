"""Geospatial analytics at table scale, written as DataFrame-to-DataFrame functions on Spark."""
