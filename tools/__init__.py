"""Developer tools (oracle check)."""
