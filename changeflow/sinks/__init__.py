"""Event sinks, versioned tables and checkpoints."""
