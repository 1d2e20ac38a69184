"""Where case tables come from and where results go."""
