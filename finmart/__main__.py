from finmart.cli import main

main()
