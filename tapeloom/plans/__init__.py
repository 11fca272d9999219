"""Named query plans over the tables and their reference SQL."""
