"""Statistics, changelog, routing, dead letters and operational figures as DataFrame operators."""
