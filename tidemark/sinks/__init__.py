"""Writers, and the splits between good rows and rejects."""
