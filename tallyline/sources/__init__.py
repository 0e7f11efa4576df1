"""Declared schemas, readers, and the mapping of the test tables onto the report inputs."""
