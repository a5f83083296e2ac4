"""Plans that put several operators in order."""
