"""From raw tables to results, built from the operators; only ``runner`` writes anything."""
