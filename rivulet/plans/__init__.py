"""Bronze -> silver -> gold compositions (one lazy plan each)."""
