"""The streaming job in its three forms."""
