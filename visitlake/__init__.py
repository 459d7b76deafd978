"""visitlake: travel-visit records, city demographics and code labels as a checked star schema."""
