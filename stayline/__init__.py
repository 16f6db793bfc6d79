"""Stayline: hospitality booking analytics as ordinary Spark DataFrame jobs."""
