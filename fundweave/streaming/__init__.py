"""File-tracked raw loads."""
