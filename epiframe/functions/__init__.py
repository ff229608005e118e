"""See the package README for what each module holds."""
