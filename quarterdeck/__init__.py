"""Peer-panel, event, experiment and forecast analytics as Spark DataFrame operators."""
