"""Query plans the driver runs, and their SQL oracles."""
