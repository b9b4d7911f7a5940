"""Mappings: which source goes through which operators into which target."""
