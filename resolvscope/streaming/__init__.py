"""The interval job over files as they arrive."""
