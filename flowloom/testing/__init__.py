"""Makers of test inputs."""
