"""Plans of the engine."""
