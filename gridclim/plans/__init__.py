"""Plans that bring foreign tables into the engine's model."""
