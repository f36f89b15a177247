"""A Spark engine that turns raw chat logs into a clean, labelled question dataset."""
