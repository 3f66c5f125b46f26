"""Jobs: operators + sources + the versioned store."""
