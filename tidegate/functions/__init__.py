"""Column functions: everything here builds Catalyst expressions and runs no job."""
