"""Plans: the full rebuild, variant presets, plan inspection, run comparison, registered queries and oracles."""
