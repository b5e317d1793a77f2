"""What is published, from what, under which checks; and the jobs that do it."""
