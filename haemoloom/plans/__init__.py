"""End-to-end plans: features, classifier and session risk."""
