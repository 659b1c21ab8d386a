"""Reading landed files into tables and writing tables back."""
