"""The named result tables and the job that builds them."""
