"""Where customer data comes from and where results go."""
